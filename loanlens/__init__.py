"""loanlens: credit-decision analytics as Spark DataFrame plans.

Wide per-decision feature rows are read, cleaned and scored, the scores are
blended into a calibrated probability of default, credit rules turn each row
into a verdict, verdicts are upserted into a master, repayment outcomes are
attached with an as-of join, and Gini, KS, PSI and KL watch the models.
"""

from loanlens import functions, operators, plans, sources

__all__ = ["functions", "operators", "plans", "sources"]
