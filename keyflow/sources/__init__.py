"""keyflow.sources"""
