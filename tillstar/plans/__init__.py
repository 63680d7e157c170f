"""The jobs: order ETL, quality gate, star schema, dashboards, verification and declared tests."""
