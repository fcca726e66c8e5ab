"""marquee: event, commerce and delivery analytics on Spark."""

# Python functions handed to Spark (the grouped pandas passes of seat
# admission, the notification state stream) are pickled by value, so
# executors run them without this package being installed on their side.
# Shipping the package with ``--py-files`` works as well.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: rely on --py-files
    pass
