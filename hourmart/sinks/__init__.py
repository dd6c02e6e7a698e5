"""hourmart.sinks"""
