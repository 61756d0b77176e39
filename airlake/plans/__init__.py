"""End-to-end runs, catalog registration, SQL reports and the query registry."""
