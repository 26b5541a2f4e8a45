"""Record sources: streams, landed files, dimension documents."""
