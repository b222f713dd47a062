"""The operators bound to the supplied tables, each with the SQL that states its result.

Every module holds ``QUERIES`` (name -> function of session and table folder) and ``ORACLE``
(name -> SQL over the same tables; missing where SQL cannot state the result).
"""

from tallyfield.plans import cohorts, logs, models, numeric, relational, scalars, scans, streams, words

MODULES = (scans, numeric, logs, words, relational, cohorts, scalars, streams, models)

QUERIES = {name: plan for module in MODULES for name, plan in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
