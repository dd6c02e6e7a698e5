"""hourmart.plans"""
