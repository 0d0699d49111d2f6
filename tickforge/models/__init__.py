"""Per-symbol forecasting models as Spark jobs.

Protocol: ``fit(windows) -> model DataFrame`` (one or a few rows per
symbol) and ``predict(windows, model) -> windows + prediction column``.
Windows carry ``symbol``, ``x`` (flattened ``ARRAY<DOUBLE>``), ``y`` and
``widx``.
"""
