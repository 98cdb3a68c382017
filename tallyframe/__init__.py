"""tallyframe: profile tables, measure catalogued variables, assemble a data dictionary.

Everything is expressed as DataFrame plans.  The driver holds configuration
(table registry, variable catalogue, enrichment maps) and never data rows.
"""
