"""hourmart.sources"""
