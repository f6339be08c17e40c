"""The registered queries: song-shaped views of the given tables, and their SQL twins."""
