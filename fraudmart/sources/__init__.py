"""fraudmart.sources"""
