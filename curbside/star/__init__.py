"""The same operators bound to a star-schema data set, with SQL to check them."""
