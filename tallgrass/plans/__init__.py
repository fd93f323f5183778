"""Ready-made queries and the storage they rely on."""
