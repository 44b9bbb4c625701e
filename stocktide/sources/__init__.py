"""Reading landed snapshot files, and the raw, warehouse and document stores."""
