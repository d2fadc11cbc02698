"""Test and benchmark workload: messy bronze tables made from the driver's tables, the
registered queries over them, and the SQL each query is checked against."""
