"""Multi-step flows, jobs, and the catalogue of registered queries
(``tabflow.plans.registry`` imports the query modules and exposes
``QUERIES`` / ``ORACLE_SQL``)."""
