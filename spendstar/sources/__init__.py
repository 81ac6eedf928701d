"""Sources and sinks: raw CSV, landing stage, generator, warehouse layers, extract."""
