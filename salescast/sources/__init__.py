"""Sources and sinks: driver tables, the order-document bridge, landing/bronze
readers and pinned-schema writers."""
