"""Send a module's functions to tasks by value, so that sizes changed in a test hold there too."""

from contextlib import contextmanager

from pyspark import cloudpickle


@contextmanager
def of(module):
    cloudpickle.register_pickle_by_value(module)
    try:
        yield
    finally:
        cloudpickle.unregister_pickle_by_value(module)
