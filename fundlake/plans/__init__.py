"""Composed plans: Silver (T1-T8), Gold (G1-G11), serving views (Q1-Q12),
the star-table adapter and the query registry."""
