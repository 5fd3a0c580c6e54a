"""strataleaf.functions"""
