"""Column functions shared by the jobs."""
