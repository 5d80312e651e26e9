"""Training-data operators: packing, joins, media, language, secrets, quality, tokenisation, URLs, token files."""
