"""strataleaf.plans"""
