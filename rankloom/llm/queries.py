"""Import every operator module, so that its query is registered."""

from importlib import import_module

from rankloom.llm import common

MODULES = (
    "vector_search", "decontamination", "sharding", "toxicity", "language", "packing", "pages", "personal", "near_copies", "repeats", "filter_audit", "chat_format", "prefix_trie",
)


def load():
    for name in MODULES:
        import_module(f"rankloom.llm.{name}")
    return common
