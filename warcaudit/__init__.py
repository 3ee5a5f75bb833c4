"""Inventory, identifier, fixity and completeness jobs for archived web content, on Spark."""
