from sitepulse.operators import distribution, histogram, joins, timeseries

__all__ = ["distribution", "histogram", "joins", "timeseries"]
