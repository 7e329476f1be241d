"""auditloom.streaming"""
