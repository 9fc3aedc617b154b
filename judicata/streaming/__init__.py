"""Stream jobs: request limiter (STR-1), trailing rates (STR-2), snapshot arrival (STR-3)."""
