"""Writers.  These, the upsert commits and the streaming ingest are the only places that run a job."""
