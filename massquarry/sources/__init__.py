"""massquarry.sources"""
