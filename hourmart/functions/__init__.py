"""hourmart.functions"""
