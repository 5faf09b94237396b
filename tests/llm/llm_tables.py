"""Where the smallest driver tables lie, and the schema of documents."""

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
