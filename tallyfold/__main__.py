from tallyfold.plans.jobs import main

main()
