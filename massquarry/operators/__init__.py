"""massquarry.operators"""
