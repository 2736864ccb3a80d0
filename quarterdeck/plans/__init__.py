"""Registered queries, oracle SQL, SQL views and the medallion job."""
