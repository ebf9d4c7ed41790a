"""Extensions for streams: windows over events with late data, and restartable upserts."""
