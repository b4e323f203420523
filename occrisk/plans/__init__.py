"""Staging views, marts, data checks, loads and exports."""
