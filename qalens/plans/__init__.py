"""Analyses, registered workloads, their SQL oracles, and plan inspection."""
