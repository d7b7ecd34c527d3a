"""Training-data operators: thirteen operators over documents, embeddings, pages and conversations."""
