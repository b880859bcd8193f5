"""Operations of a training-data pipeline: filters, near-duplicate search,
decontamination, sanitising, mixing, sharding and chat formatting.

Nothing else in the library imports this subpackage; its queries are in
``tessera.llm.queries`` and the end-to-end run in ``corpus_pipeline``.
"""
