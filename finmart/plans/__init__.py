"""End-to-end dataset jobs: lazy frames in, a lazy frame out; the caller reads and writes."""
