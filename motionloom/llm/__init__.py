"""Training-data operators: text, embeddings, archives and token files at corpus scale."""
