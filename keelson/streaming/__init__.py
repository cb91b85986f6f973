from keelson.streaming.drift import baseline_profile, drift_stream, window_drift, windowed_drift  # noqa: F401
from keelson.streaming.scoring import score_requests, score_stream, scored_stream  # noqa: F401
from keelson.streaming.serving import serve_production  # noqa: F401
