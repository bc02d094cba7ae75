"""Jobs for ``spark-submit``; each module has a ``main``."""
