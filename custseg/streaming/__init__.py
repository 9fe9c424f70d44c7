from .scoring import score_stream  # noqa: F401
