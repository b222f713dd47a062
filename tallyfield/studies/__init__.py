"""Ready-made reports over tables with the schemas of the schema registry.

``plans`` runs the operators on the supplied tables; these modules run them on tables shaped like
the registered schemas (gems, films, a university, payments, classifier training sets).
"""
