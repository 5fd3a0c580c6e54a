"""strataleaf.sources"""
