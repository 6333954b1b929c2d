"""sendero: data-frame, text, streaming, learning and graph jobs written for Spark."""
