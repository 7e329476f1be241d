"""auditloom.plans"""
