"""Operators for preparing language-model training data at scale.

Nothing outside this subpackage imports it.  Each module holds one operator; ``catalog`` registers
their queries.  Tasks import these modules, so executors need the package: install it there, set
``PYTHONPATH``, or call :func:`locusflow.llm.shipping.ship` once per session.
"""
