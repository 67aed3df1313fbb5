"""Training-data operators.

Each module is one operator with its own interface; ``registry`` holds the
``opN_<name>`` queries over the shared tables.  Nothing else in the library
imports this subpackage.
"""
