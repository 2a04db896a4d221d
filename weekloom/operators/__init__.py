"""DataFrame -> DataFrame operators. Import the modules, e.g. ``operators.rollup``."""
