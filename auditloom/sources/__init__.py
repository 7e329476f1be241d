"""auditloom.sources"""
