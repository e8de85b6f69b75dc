"""Late arrivals. They are a property of batches here; there is no stream to keep state for."""
