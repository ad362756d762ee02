"""Writing outputs so that a batch is visible as a whole or not at all."""
