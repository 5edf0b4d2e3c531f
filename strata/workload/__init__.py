"""The library at work on the benchmark tables: views, queries and their SQL oracles."""
