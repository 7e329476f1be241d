"""auditloom: a Spark-native engine for security-finding analytics.

Every stage is a function ``DataFrame -> DataFrame``; Catalyst picks the physical plan.
"""
