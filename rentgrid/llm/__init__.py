"""Training-data operators: one module each, their registered queries in ``queries``.

Nothing else in the package imports this subpackage. Task functions are pickled
by value, so executors need the third-party libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
