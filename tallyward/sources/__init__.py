"""Reading tables; writing layers and reports."""
