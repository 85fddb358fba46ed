"""Outputs: versioned warehouse tables and the quarantine."""
