from zonehour.streaming.ingest import stream_clean_trips, stream_clean_weather

__all__ = ["stream_clean_trips", "stream_clean_weather"]
