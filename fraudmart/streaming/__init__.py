"""fraudmart.streaming"""
