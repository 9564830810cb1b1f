"""fraudmart.operators"""
