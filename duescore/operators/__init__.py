"""DataFrame -> DataFrame operators: enrichment joins, contact activity, outcomes, nested debts,
features and scoring.  None of them runs an action."""
