"""The models: staging, marts and their build order."""
