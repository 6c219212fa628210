"""Row shapes that pass between sources, operators and plans."""

DOCS = "uri string, title string, mime string, text string, raw_bytes binary, meta map<string,string>"
CHUNKS = "chunk_id long, source_uri string, ordinal int, text string"
STATE = "seq long, collection string, uri string, state string, dim int, n_chunks int, error string, updated_at timestamp"
GOLDEN = "query_id long, query string, relevant_uris array<string>"
HITS = "query_id long, rank int, chunk_id long, score double"
STATES = ("discovered", "extracted", "gated", "chunked", "embedded", "stored", "skipped", "error")
