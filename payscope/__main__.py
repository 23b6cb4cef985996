from payscope.plans.run import main

main()
