"""The analyses, from typed input tables to results."""
