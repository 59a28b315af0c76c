"""cardlake: a card-spend lakehouse library built on Spark DataFrames.

Layers: landing files -> bronze (typed, append-only) -> silver (one row per
natural key) -> gold (star schema, orphans split off) -> warehouse (surrogate
keys, hash-diff upserts, daily and monthly aggregates) -> controls -> measures.
"""
