from tillsense.streaming.refresh import bootstrap, incremental_refresh, refresh_batch

__all__ = ["bootstrap", "incremental_refresh", "refresh_batch"]
