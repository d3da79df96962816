"""The live path over the audit log."""
