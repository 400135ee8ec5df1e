"""Jobs: raw ingest, the four structured tables, features and quality reports."""
