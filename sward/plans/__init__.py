"""End-to-end plans: cross-validation, scoring and feature-table builds."""
