"""Steps of a daily run: transformations tied to tables. Actions happen here and in ``sources`` only."""
