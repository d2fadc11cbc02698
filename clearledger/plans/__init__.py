"""Multi-operator jobs: one cleaning job per entity, and the quality reports."""
