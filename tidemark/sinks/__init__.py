"""Writers: files, documents, topics, keyed upserts."""
