"""What any split must satisfy, whatever the way it was found."""


def check_split(text, chunks, size=1000, overlap=200):
    """Chunks are stripped, long enough, bounded, and together say the whole text in order."""
    assert all(c == c.strip() and len(c) > 10 for c in chunks)
    assert all(len(c) <= size + (overlap + 1 if overlap else 0) for c in chunks)
    if not text.strip():
        assert chunks == []
    if len(text) <= size:
        assert chunks == ([text.strip()] if len(text.strip()) > 10 else [])
    if not overlap:
        at = 0
        for chunk in chunks:  # slices of the text, one behind the other
            at = text.index(chunk, at) + len(chunk)
