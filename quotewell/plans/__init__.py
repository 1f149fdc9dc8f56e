"""End-to-end pipelines and the catalogue of registered queries."""
