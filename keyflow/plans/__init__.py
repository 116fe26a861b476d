"""keyflow.plans"""
