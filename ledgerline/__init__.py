"""Accounts-payable analytics on Spark: bronze landing, silver cleaning, gold reports, risk scoring."""
