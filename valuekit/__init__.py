"""valuekit: PySpark operators that clean seasonal tables, match entities, attach dated values,
train valuation models and report where predicted and actual values part."""
