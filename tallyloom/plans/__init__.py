"""Composed plans: retail analytics, dataset onboarding, the query catalogue."""
