"""Operators for preparing language-model training data, and the queries that apply them.

``tables``, ``words`` and ``components`` are shared helpers; every other module is one operator.
``queries`` binds the operators to the supplied tables. Nothing outside this package imports it.
"""
