"""keyflow.operators"""
