"""Reading tables and uploads, staging, versioned writes and report parameters."""
