"""hourmart.operators"""
