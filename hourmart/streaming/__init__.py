"""hourmart.streaming"""
