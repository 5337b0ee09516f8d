from .dedupe import dedupe_by_key, latest_by_key  # noqa: F401
