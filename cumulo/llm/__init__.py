"""llm: operators of a training-data pipeline (identify, clean, dedup, tokenise, shard, format).

Modules are imported one by one; nothing else in the library imports this package.
"""
