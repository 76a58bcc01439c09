from parcelight.streaming.arrivals import append_arrivals

__all__ = ["append_arrivals"]
