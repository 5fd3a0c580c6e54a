"""strataleaf.streaming"""
