"""Jobs (KPI refresh, resync, report) and the catalogue of registered queries."""
