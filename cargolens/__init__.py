"""cargolens: shipment-event analytics as composable Spark DataFrame transforms.

Layers (bronze -> silver -> gold -> checks -> consumption) are plain
``DataFrame -> DataFrame`` functions; only the sinks and the end-to-end run
perform actions or I/O.
"""

__version__ = "0.1.0"
