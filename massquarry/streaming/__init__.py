"""massquarry.streaming"""
