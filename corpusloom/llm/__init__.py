"""Training-data pipeline operators (near-duplicate removal, tokenizing, packing, quality and toxicity models).

Nothing outside this folder imports it; ``queries`` holds the registered queries and their SQL.
"""
