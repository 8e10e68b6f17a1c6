"""massquarry.functions"""
