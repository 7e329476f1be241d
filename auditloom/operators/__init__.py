"""auditloom.operators"""
