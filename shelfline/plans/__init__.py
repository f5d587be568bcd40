"""Multi-step plans: exact order statistics at scale, and end-to-end flows."""
