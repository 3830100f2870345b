"""The jobs: cleansing, enrichment, message consumers, snapshots, dating and reports."""
