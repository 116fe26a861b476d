"""keyflow.functions"""
