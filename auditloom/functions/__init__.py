"""auditloom.functions"""
