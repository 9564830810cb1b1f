"""fraudmart.plans"""
