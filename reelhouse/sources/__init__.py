from . import domain, files, sinks  # noqa: F401
