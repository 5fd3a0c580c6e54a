"""strataleaf.operators"""
