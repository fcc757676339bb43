"""Jobs: the steps that carry tables from layer to layer, and the questions on the result."""
