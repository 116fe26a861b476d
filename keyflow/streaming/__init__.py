"""keyflow.streaming"""
